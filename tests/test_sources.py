import os
import struct
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import vocab as V
from tessera.plans import io_queries
from tessera.sources import cache as C
from tessera.sources import captions as CAP
from tessera.sources import images as IMG


def test_csv_quotes_newlines_na_empty(spark, tmp):
    path = os.path.join(tmp, "captions.csv")
    with open(path, "w") as f:
        f.write('image,caption\n'
                'a.jpg,"A ""big"" dog, running ."\n'
                'a.jpg,"two\nlines"\n'
                'b.jpg,NA\n'
                'b.jpg,\n')
    rows = sorted(CAP.read_captions(spark, path).collect(), key=lambda r: (r["key"], r["caption_no"]))
    assert [(r["key"], r["caption_no"]) for r in rows] == [("a.jpg", 0), ("a.jpg", 1), ("b.jpg", 0), ("b.jpg", 1)]
    assert rows[0]["caption"] == 'A "big" dog, running .'
    assert rows[1]["caption"] == "two\nlines"
    assert rows[2]["caption"] == "NA" and rows[3]["caption"] is None
    df = CAP.read_captions(spark, path)
    assert CAP.drop_missing(df).count() == 3
    assert CAP.missing_counts(df).first()["dropped"] == 1


def _write(tmp, name, text):
    path = os.path.join(tmp, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_columns_are_found_by_name(spark, tmp):
    want = [("a.jpg", 0, "one"), ("a.jpg", 1, "two"), ("b.jpg", 0, "three")]
    texts = {"plain": "image,caption\na.jpg,one\na.jpg,two\nb.jpg,three\n",
             "swapped": "caption,image\none,a.jpg\ntwo,a.jpg\nthree,b.jpg\n",
             "extra": "id,image,split,caption\n1,a.jpg,x,one\n2,a.jpg,y,two\n3,b.jpg,z,three\n"}
    for name, text in texts.items():
        path = _write(tmp, f"{name}.csv", text)
        for multi_line in (True, False):
            rows = CAP.read_captions(spark, path, multi_line=multi_line).collect()
            assert sorted((r["key"], r["caption_no"], r["caption"]) for r in rows) == want, name


def test_csv_without_a_column_is_an_error(spark, tmp):
    path = _write(tmp, "short.csv", "image,text\na.jpg,one\n")
    with pytest.raises(ValueError, match="caption"):
        CAP.read_captions(spark, path)
    folder = os.path.join(tmp, "mixed")
    os.makedirs(folder)
    _write(folder, "a.csv", "image,caption\na.jpg,one\n")
    _write(folder, "b.csv", "caption,image\ntwo,b.jpg\n")
    with pytest.raises(Exception, match="(?i)header"):
        CAP.read_captions(spark, folder).collect()


def test_split_files_keep_their_line_order(spark, tmp):
    path = _write(tmp, "long.csv", "image,caption\n" + "".join(f"k{i % 3},line {i}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = CAP.read_captions(spark, path, multi_line=False)
        got = {(r["key"], r["caption_no"]): r["caption"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {(f"k{i % 3}", i // 3): f"line {i}" for i in range(3000)}


def test_image_weights_are_built_once_a_size(spark, monkeypatch):
    built = []
    real = IMG.resize_weights
    monkeypatch.setattr(IMG, "resize_weights", lambda *a: built.append(a) or real(*a))
    run = []
    df = spark.createDataFrame([(i, 2, 2, 1, bytearray(4)) for i in range(50)], "key int, height int, width int, n_channels int, data binary")
    monkeypatch.setattr(type(df), "mapInPandas", lambda self, f, schema: run.append(f) or self)
    IMG.normalize_images(df, (4, 4))
    list(run[0](iter([df.toPandas()])))
    assert built == [(2, 4)]


def _png(path, arr):
    h, w, c = arr.shape
    color = {1: 0, 3: 2, 4: 6}[c]
    raw = b"".join(b"\x00" + arr[y].tobytes() for y in range(h))

    def chunk(t, d):
        return struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d) & 0xFFFFFFFF)
    data = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    with open(path, "wb") as f:
        f.write(data)


def test_images_channels_and_normalize(spark, tmp):
    d = os.path.join(tmp, "img")
    os.makedirs(d)
    rgb = np.zeros((6, 5, 3), np.uint8)
    rgb[..., 0] = 200                                 # pure red
    _png(os.path.join(d, "rgb.png"), rgb)
    _png(os.path.join(d, "gray.png"), np.full((4, 4, 1), 51, np.uint8))
    rgba = np.zeros((3, 3, 4), np.uint8)
    rgba[..., 2] = 255
    rgba[..., 3] = 10
    _png(os.path.join(d, "rgba.png"), rgba)
    with open(os.path.join(d, "bad.png"), "wb") as f:
        f.write(b"not an image")
    imgs = IMG.read_images(spark, d)
    got = {r["key"]: r["n_channels"] for r in imgs.collect()}
    assert got == {"rgb.png": 3, "gray.png": 1, "rgba.png": 4}
    norm = {r["key"]: np.array(r["pixels"]).reshape(8, 8, 3) for r in IMG.normalize_images(imgs, (8, 8)).collect()}
    assert np.allclose(norm["rgb.png"][..., 0], 200 / 255, atol=1e-6) and np.allclose(norm["rgb.png"][..., 1:], 0)
    assert np.allclose(norm["gray.png"], 51 / 255, atol=1e-6)
    assert np.allclose(norm["rgba.png"][..., 2], 1.0) and np.allclose(norm["rgba.png"][..., :2], 0)


def test_resize_weights_rows_sum_to_one():
    for n_in, n_out in [(500, 224), (100, 224), (224, 224)]:
        w = IMG.resize_weights(n_in, n_out)
        assert w.shape == (n_out, n_in) and np.allclose(w.sum(axis=1), 1.0)


def test_cache_reuses_then_invalidates(spark, tmp):
    src = os.path.join(tmp, "src")
    spark.createDataFrame([(1, 0, "a b")], "key bigint, caption_no bigint, caption string").write.parquet(src)
    calls = []

    def compute():
        calls.append(1)
        return V.word_counts(spark.read.parquet(src))

    cache = os.path.join(tmp, "cache")
    C.materialize_once(spark, compute, cache, [spark.read.parquet(src)]).collect()
    C.materialize_once(spark, compute, cache, [spark.read.parquet(src)]).collect()
    assert len(calls) == 1
    spark.createDataFrame([(2, 0, "c")], "key bigint, caption_no bigint, caption string").write.mode("append").parquet(src)
    out = C.materialize_once(spark, compute, cache, [spark.read.parquet(src)])
    assert len(calls) == 2 and out.count() == 3


def test_extract_missing_scores_each_key_once(spark, tmp):
    keys = spark.range(10).select(F.col("id").alias("key"))
    scored = []

    def score(df):
        scored.append(df.count())
        return df.withColumn("v", F.col("key") * 2)

    done = os.path.join(tmp, "done")
    C.extract_missing(spark, keys.filter("key < 4"), done, score)
    out = C.extract_missing(spark, keys, done, score)
    assert scored == [4, 6] and out.count() == 10


def test_normalize_keeps_key_name_and_type(spark):
    # bigint keys under another name, one gray and one BGR pixel row
    df = spark.createDataFrame([(7, 1, 2, 1, bytes([0, 255])), (8, 1, 1, 3, bytes([10, 20, 30]))],
                               "item bigint, height int, width int, n_channels int, data binary")
    out = {r["item"]: r["pixels"] for r in IMG.normalize_images(df, (2, 1), key="item").collect()}
    assert dict(IMG.normalize_images(df, (2, 1), key="item").dtypes)["item"] == "bigint"
    assert np.allclose(out[7], [0, 0, 0, 1, 1, 1])
    assert np.allclose(out[8], [30 / 255, 20 / 255, 10 / 255] * 2, atol=1e-6)


def test_fingerprint_follows_the_files(spark, tmp):
    folder = os.path.join(tmp, "t")
    spark.range(100).repartition(4).write.parquet(folder)
    df = lambda: spark.read.parquet(folder).select((spark.range(1).count() + C.F.col("id")).alias("x"))
    first = C.fingerprint(spark, [df()], "p")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert C.fingerprint(spark, [df()], "p") == first  # files in another order and grouping
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert C.fingerprint(spark, [df()], "q") != first
    counted = df().groupBy("x").count()  # an aggregate has no hidden columns
    second = C.fingerprint(spark, [counted])
    spark.range(5).write.mode("append").parquet(folder)
    grown = C.fingerprint(spark, [df()], "p")
    assert grown != first and C.fingerprint(spark, [df().groupBy("x").count()]) != second
    part = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))[0]
    os.utime(os.path.join(folder, part), (1, 1))
    touched = C.fingerprint(spark, [df()], "p")
    assert touched not in (first, grown)
    os.rename(os.path.join(folder, part), os.path.join(folder, "renamed.parquet"))
    assert C.fingerprint(spark, [df()], "p") != touched
    assert C.fingerprint(spark, [spark.range(3)], "p") == C.fingerprint(spark, [spark.range(9)], "p")


def test_the_check_for_quoted_newlines_chooses_the_reader(spark, tmp):
    plain = _write(tmp, "plain.csv", 'image,caption\na.jpg,"say ""hi"""\na.jpg,two\n')
    broken = _write(tmp, "broken.csv", 'image,caption\na.jpg,"two\nlines"\n')
    assert not CAP.has_quoted_newlines(spark, plain) and CAP.has_quoted_newlines(spark, broken)
    for path, want in ((plain, ['say "hi"', "two"]), (broken, ["two\nlines"])):
        rows = CAP.read_captions(spark, path, multi_line=None).orderBy("caption_no").collect()
        assert [r["caption"] for r in rows] == want


def test_image_files_are_those_of_sparks_text_writer(spark, tmp_path, monkeypatch):
    """Repeated and null ids, a null vector: same folders and bytes; and the files are dealt to several tasks."""
    rows = [(i, [float((i * j) % 7 - 3) for j in range(64)]) for i in range(250)] + [(3, [1.0] * 64), (None, [-1.0] * 64), (900, None)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")

    def written():
        folder = io_queries._bitmap_files(spark, str(tmp_path)).removeprefix("file:")
        found = sorted(p for p in Path(folder).glob("key=*/[!._]*"))
        return {p.parent.name: sorted(p.read_bytes().split(b"\n")) for p in found}, len(found)

    tasks, run = spark.sparkContext.accumulator(0), io_queries._folder_writer

    def counted(out):
        write = run(out)

        def each(batches):
            tasks.add(1)
            return write(batches)
        return each

    monkeypatch.setattr(io_queries, "_folder_writer", counted)
    by_arrow = written()
    assert tasks.value > 1 and by_arrow[1] == 252
    monkeypatch.setattr(io_queries, "_known_to_arrow", lambda path: False)
    assert written() == by_arrow
