"""Registered queries for sources, caches, scoring, streaming and reports.

Each reads the stand-in tables (or files Spark writes from them into the session's
checkpoint folder) and has a DuckDB oracle on the original tables.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from tessera.operators import report as R
from tessera.operators import scoring as SC
from tessera.operators import vocab as V
from tessera.plans import evaluate as EV
from tessera.plans import generate as GEN
from tessera.plans import sqlparts as Q
from tessera.plans import vectors as VEC
from tessera.sources import cache as C
from tessera.sources import captions as CAP
from tessera.sources import images as IMG
from tessera.sources import tables
from tessera.streaming import pipelines as P

SEED, TEST, NUM_WORDS, K = 42, 0.2, 10000, 5
CHUNK = 4
#: Image files that a task writes, and that a core reads in a micro-batch.
FILES_PER_TASK = 100
FILES_PER_CORE = 200


def chunk_mean_model():
    """A fixed stand-in encoder: mean of each run of 4 inputs (64 floats -> 16)."""
    def predict(batch: np.ndarray) -> np.ndarray:
        b = np.asarray(batch, dtype=np.float64)
        return b.reshape(b.shape[0], -1, CHUNK).mean(axis=2).astype(np.float32)
    return predict


def _feature_summary(df, col="features"):
    return df.select("key", F.size(col).alias("n_dim"),
                     F.round(F.aggregate(col, F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double")), 6)
                     .alias("f_sum"))


def _split_train(spark, sf):
    c = tables.captions(spark, sf)
    tr, va = EV.split_sides(c, "key", TEST, SEED)
    return c, tr, va


def q_read_captions(spark, sf):
    """Captions written as CSV (image, caption) and read back with numbering by file order."""
    out = P.scratch_path(spark, "captions-csv")
    src = tables.table(spark, sf, "conversations")
    (src.orderBy("conv_id", "turn")
     .select(F.col("conv_id").cast("string").alias("image"), F.col("text").alias("caption"))
     .write.option("header", True).option("escape", '"').csv(out))
    return CAP.read_captions(spark, out)


def q_missing_counts(spark, sf):
    return CAP.missing_counts(tables.captions(spark, sf))


def q_by_index(spark, sf):
    return R.by_index(tables.captions(spark, sf), 3).select("key", "caption_no", "caption")


def q_show_captions(spark, sf):
    c = tables.captions(spark, sf)
    first_val = EV.split_sides(c, "key", TEST, SEED)[1].agg(F.min("key")).first()[0]
    return R.show_captions(c, first_val).select("key", "caption_no", "caption")


def q_prediction_report(spark, sf):
    c = tables.captions(spark, sf)
    pred = EV.predict_captions(c, tables.features(spark, sf), K, test=TEST, seed=SEED)
    pred = pred.select(F.col("query").alias("key"), F.col("caption").alias("predicted"))
    return R.prediction_report(pred, c, 5, 7)


def q_extract_features(spark, sf):
    e = tables.table(spark, sf, "embeddings").select(F.col("vec_id").alias("key"), "embedding")
    return _feature_summary(SC.extract_features(e, chunk_mean_model, "embedding", batch_size=32,
                                                input_shape=[64]))


def q_extract_missing(spark, sf):
    """Score the training keys first, then ask for all keys: each key is scored exactly once."""
    c, tr, _ = _split_train(spark, sf)
    e = tables.table(spark, sf, "embeddings").select(F.col("vec_id").alias("key"), "embedding")
    done = P.scratch_path(spark, "features")

    def score(df):
        return SC.extract_features(df, chunk_mean_model, "embedding", input_shape=[64]).select("key", "features")

    C.extract_missing(spark, e.join(tr, "key", "left_semi"), done, score)
    return _feature_summary(C.extract_missing(spark, e, done, score))


def q_vocabulary_cached(spark, sf):
    """The training vocabulary through materialize_once: computed, then read back."""
    c, tr, _ = _split_train(spark, sf)
    train = EV.caption_side(c, "train", "key", TEST, SEED)
    path = P.scratch_path(spark, "vocab-cache")
    first = C.materialize_once(spark, lambda: V.build_vocabulary(train, NUM_WORDS), path, [c], "vocab:10000")
    first.count()
    return C.materialize_once(spark, lambda: V.build_vocabulary(train, NUM_WORDS), path, [c], "vocab:10000")


def q_encode_stream(spark, sf):
    """All captions, streamed from the conversations file, encoded with the training vocabulary."""
    c, tr, _ = _split_train(spark, sf)
    vocab = V.build_vocabulary(EV.caption_side(c, "train", "key", TEST, SEED), NUM_WORDS)
    schema = tables.table(spark, sf, "conversations").schema
    stream = P.file_stream(spark, f"{sf}/conversations.parquet", schema).select(
        F.col("conv_id").alias("key"), F.col("turn").alias("caption_no"), F.col("text").alias("caption"))
    out = P.scratch_path(spark, "encoded-stream")
    q = P.encode_stream(stream, vocab, out, P.scratch_path(spark, "ckpt"))
    q.awaitTermination()
    enc = spark.read.parquet(out)
    return enc.select("key", "caption_no", F.size("tokens").alias("n_tokens"),
                      F.array_join(F.col("tokens").cast("array<string>"), " ").alias("tokens"))


def q_features_stream(spark, sf):
    schema = tables.table(spark, sf, "embeddings").schema
    stream = P.file_stream(spark, f"{sf}/embeddings.parquet", schema).select(
        F.col("vec_id").alias("key"), F.col("embedding").alias("features_in"))
    out = P.scratch_path(spark, "features-stream")
    q = P.features_stream(stream, chunk_mean_model, out, P.scratch_path(spark, "ckpt"), input_shape=[64])
    q.awaitTermination()
    return _feature_summary(spark.read.parquet(out))


def q_score_sequences(spark, sf):
    """A caller model (the corpus bigram argmax as a lookup array) decoded with mapInPandas."""
    c, tr, va = _split_train(spark, sf)
    vocab, _, corpus, _ = GEN.corpus_model(EV.caption_side(c, "train", "key", TEST, SEED), NUM_WORDS)
    start, end = GEN.marker_id_values(vocab)
    table = np.zeros(NUM_WORDS, dtype=np.int64)
    for r in corpus.collect():          # bounded by the vocabulary size
        table[r["c1"]] = r["next"]

    def make():
        def step(feats, seq):
            scores = np.zeros((seq.shape[0], NUM_WORDS), dtype=np.float32)
            scores[np.arange(seq.shape[0]), table[seq[:, -1]]] = 1.0
            return scores
        return step

    f = tables.features(spark, sf).join(va, "key", "left_semi")
    out = SC.score_sequences(f, make, start, end, max_tokens=30)
    return out.select("key", F.size("tokens").alias("n_tokens"),
                      F.array_join(F.col("tokens").cast("array<string>"), " ").alias("tokens"))


def _image_rows(spark, sf):
    """Spark image structs derived from each vector: values scaled to bytes 0..255 per vector,
    as an 8 x 8 gray image and an 8 x 8 BGR image of three arrangements of the values."""
    e = tables.table(spark, sf, "embeddings").select(F.col("vec_id").alias("key"), "embedding")
    # double arithmetic on both engines, so the byte values agree exactly
    lo, hi = F.array_min("embedding").cast("double"), F.array_max("embedding").cast("double")
    span = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
    byts = F.transform("embedding", lambda x: F.round((x.cast("double") - lo) / span * 255).cast("int"))
    as_binary = lambda a: F.unhex(F.array_join(F.transform(a, lambda b: F.lpad(F.hex(b), 2, "0")), ""))
    b = e.select("key", byts.alias("b"))
    gray = b.select("key", F.lit("gray").alias("kind"), F.lit(8).alias("height"), F.lit(8).alias("width"),
                    F.lit(1).alias("n_channels"), as_binary(F.col("b")).alias("data"))
    colours = F.flatten(F.transform("b", lambda x, i: F.array(x, F.get("b", 63 - i), 255 - x)))
    bgr = b.select("key", F.lit("bgr").alias("kind"), F.lit(8).alias("height"), F.lit(8).alias("width"),
                   F.lit(3).alias("n_channels"), as_binary(colours).alias("data"))
    return gray.unionByName(bgr)


def q_normalize_images(spark, sf):
    """O5 on Spark-derived image structs, kept at their size (so resampling is the identity):
    gray is replicated to three channels, BGR is reordered to RGB, bytes become floats / 255."""
    imgs = _image_rows(spark, sf)
    out = []
    for kind, size in (("gray", (8, 8)), ("bgr", (8, 8))):
        part = imgs.filter(F.col("kind") == kind).drop("kind")
        out.append(IMG.normalize_images(part, size).select(
            "key", F.lit(kind).alias("kind"), "height", "width", "channels",
            F.size("pixels").alias("n_values"),
            F.round(F.aggregate("pixels", F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double")), 6)
            .alias("v_sum"),
            F.array_join(F.transform(F.slice("pixels", 1, 3), lambda v: F.round(v.cast("double"), 6)
                                     .cast("string")), " ").alias("first_pixel")))
    return out[0].unionByName(out[1])


def _bitmap_files(spark, sf) -> str:
    """Image files that Spark derives from the vectors, one for each, in a folder ``key=<id>``.

    A wireless bitmap is a short header and one bit per pixel. Row r of an 8 x 10 bitmap holds the signs of
    values 7r+1 to 7r+7 behind a black pixel, so all bytes are ASCII and the text writer can write them; its
    newline is the last row. The number of tasks follows from the number of files, since making a file
    takes far longer than its bytes. Hadoop starts a process or two for each file it makes on a
    file system without native code, so the tasks write through Arrow where that knows the path's file system.
    """
    out = P.scratch_path(spark, "bitmaps")
    e = tables.table(spark, sf, "embeddings").select(F.col("vec_id").alias("key"), "embedding")
    row = lambda r: F.aggregate(F.slice("embedding", r * 7 + 1, 7), F.lit(0), lambda a, v: a * 2 + (v > 0).cast("int"))
    data = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(8)), lambda r: F.chr(row(r))), "")
    header = F.concat(*[F.chr(F.lit(b)) for b in (0, 0, 8, 10)])
    tasks = math.ceil(max(e.count(), 1) / FILES_PER_TASK)
    files = e.select("key", F.concat(header, data).alias("value")).repartition(tasks, "key")
    if _known_to_arrow(out):
        files.sortWithinPartitions("key").mapInArrow(_folder_writer(out), "files long").agg(F.sum("files")).collect()
    else:
        files.write.partitionBy("key").text(out)
    return out


def _known_to_arrow(path: str) -> bool:
    try:
        fs.FileSystem.from_uri(path)
    except (pa.ArrowException, OSError, ImportError):
        return False
    return True


def _folder_writer(out: str):
    """Writes rows (key, value) sorted by key as Spark's text writer would: a folder and a file for each key, a line a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(out)
        rows = ((k, v) for b in batches for k, v in zip(*(c.to_pylist() for c in b.columns), strict=True))
        n = 0
        for key, lines in itertools.groupby(rows, key=lambda r: r[0]):
            folder = f"{root}/key={'__HIVE_DEFAULT_PARTITION__' if key is None else key}"
            store.create_dir(folder)
            with store.open_output_stream(f"{folder}/part-0.txt") as f:
                for _, line in lines:
                    f.write(((line or "") + "\n").encode())
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])
    return run


def _key_of_folder(df):
    return df.withColumn("key", F.regexp_replace("key", "^key=", "").cast("bigint"))


def q_read_images(spark, sf):
    """O4: files decoded by Spark's image source; the white pixels of each, and its first row."""
    imgs = _key_of_folder(IMG.read_images(spark, _bitmap_files(spark, sf), recursive=True, key_part=-2))
    white = F.length(F.hex("data")) - F.length(F.replace(F.hex("data"), F.lit("F"), F.lit("")))
    return imgs.select("key", "height", "width", "n_channels", (white / 6).cast("int").alias("n_white"),
                       F.substring(F.hex("data"), 1, 48).alias("first_row"))


def row_mean_model():
    """A fixed stand-in encoder: the mean of each row of pixels (rows, columns, channels)."""
    def predict(batch: np.ndarray) -> np.ndarray:
        return np.asarray(batch, dtype=np.float64).mean(axis=(2, 3)).astype(np.float32)
    return predict


def q_image_vectors(spark, sf):
    """Image files to stored vectors as a batch: half of them first, then all; each is scored once."""
    files, store = _bitmap_files(spark, sf), P.scratch_path(spark, "image-vectors")
    for part in ("key=*[02468]", "*"):
        found = VEC.image_vectors(spark, f"{files}/{part}", row_mean_model, store, (8, 10), recursive=True, key_part=-2)
    return _feature_summary(_key_of_folder(found))


def q_image_vectors_stream(spark, sf):
    """The same as a stream: every file once, also after a restart."""
    files, store, ckpt = _bitmap_files(spark, sf), P.scratch_path(spark, "image-vectors"), P.scratch_path(spark, "ckpt")
    max_files = FILES_PER_CORE * spark.sparkContext.defaultParallelism  # a batch has a fixed cost, whatever the cores
    for _ in range(2):
        VEC.image_vectors_stream(spark, files, row_mean_model, store, ckpt, (8, 10), recursive=True, key_part=-2,
                                 max_files=max_files).awaitTermination()
    return _feature_summary(_key_of_folder(spark.read.parquet(store)))


def top_values_model():
    """A decoder that reads its vector: the position (from 1) of the largest value not yet chosen."""
    def step(feats: np.ndarray, seq: np.ndarray) -> np.ndarray:
        scores = np.concatenate([np.full((len(feats), 1), -np.inf), feats], axis=1)
        np.put_along_axis(scores, seq, -np.inf, axis=1)
        return scores
    return step


def q_score_vectors(spark, sf):
    """O37 with a model whose every step depends on the vector and on the tokens before."""
    out = SC.score_sequences(tables.features(spark, sf), top_values_model, 0, 7, max_tokens=30)
    return out.select("key", F.size("tokens").alias("n_tokens"),
                      F.array_join(F.col("tokens").cast("array<string>"), " ").alias("tokens"))


def q_resize_images(spark, sf):
    """O5 at other sizes: 8 x 8 images made 5 wide and 3 high (filtered down) and 11 x 12 (up)."""
    gray = _image_rows(spark, sf).filter("kind = 'gray'").drop("kind")
    out = [IMG.normalize_images(gray, size).select(
        "key", "height", "width", F.array_join(F.transform("pixels", lambda v: F.round(v.cast("double") * 255).cast("int").cast("string")), " ")
        .alias("pixels")) for size in ((5, 3), (11, 12))]
    return out[0].unionByName(out[1])


QUERIES = {
    "read_images": q_read_images,
    "image_vectors": q_image_vectors,
    "image_vectors_stream": q_image_vectors_stream,
    "score_vectors": q_score_vectors,
    "resize_images": q_resize_images,
    "normalize_images": q_normalize_images,
    "read_captions": q_read_captions,
    "missing_counts": q_missing_counts,
    "by_index": q_by_index,
    "show_captions": q_show_captions,
    "prediction_report": q_prediction_report,
    "extract_features": q_extract_features,
    "extract_missing": q_extract_missing,
    "vocabulary_cached": q_vocabulary_cached,
    "encode_stream": q_encode_stream,
    "features_stream": q_features_stream,
    "score_sequences": q_score_sequences,
}

_WITH = f"WITH {Q.captions_cte()}, {Q.split_cte(SEED, TEST)}, {Q.train_cte()}"
_FEAT_SQL = f"""
SELECT vec_id AS key, CAST(16 AS INTEGER) AS n_dim,
       round(list_reduce(list_prepend(0.0::DOUBLE,
             list_transform(range(16), lambda j: CAST(CAST(list_avg(embedding[4 * j + 1:4 * j + 4]::DOUBLE[]) AS FLOAT) AS DOUBLE))),
             lambda a, b: a + b), 6) AS f_sum
FROM embeddings"""

_IMG_BYTES = """bytes AS (
  SELECT vec_id AS key,
         list_transform(e, lambda x: CAST(round((x - list_min(e))
             / CASE WHEN list_max(e) > list_min(e) THEN list_max(e) - list_min(e) ELSE 1.0 END * 255)
             AS INTEGER)) AS b
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
),
px AS (
  SELECT key, 'gray' AS kind, 8 AS height, 8 AS width,
         flatten(list_transform(b, lambda v: [v, v, v])) AS rgb FROM bytes
  UNION ALL
  SELECT key, 'bgr', 8, 8,
         flatten(list_transform(range(64), lambda i: [255 - b[i + 1], b[64 - i], b[i + 1]])) FROM bytes
),
f AS (SELECT key, kind, height, width, list_transform(rgb, lambda v: CAST(CAST(v / 255.0 AS FLOAT) AS DOUBLE)) AS p
      FROM px)"""

_BITMAP = """rows AS (
  SELECT vec_id AS key, list_transform(range(9), lambda r: list_transform(embedding[r * 7 + 1:r * 7 + 7], lambda v: CASE WHEN v > 0 THEN 1 ELSE 0 END)) AS b
  FROM embeddings),
counts AS (SELECT key, list_append(list_transform(b, lambda r: list_sum(r)), 2) AS n, b[1] AS first FROM rows)"""
_IMAGE_VECTORS = f"""WITH {_BITMAP}
SELECT key, CAST(10 AS INTEGER) AS n_dim, round(list_sum(list_transform(n, lambda x: x / 8.0)), 6) AS f_sum FROM counts"""

#: The weights of the filter as the published formula states them: sinc(x) sinc(x / 3) inside three lobes, widened when shrinking.
_LANCZOS = """
  SELECT o, i, w / sum(w) OVER (PARTITION BY o) AS w FROM (
    SELECT o, i, CASE WHEN x = 0 THEN 1.0 WHEN abs(x) >= 3 THEN 0.0
                      ELSE sin(pi() * x) / (pi() * x) * sin(pi() * x / 3) / (pi() * x / 3) END AS w
    FROM (SELECT o, i, ((i + 0.5) - (o + 0.5) * (8.0 / {n})) / greatest(8.0 / {n}, 1.0) AS x
          FROM range({n}) a(o), range(8) b(i)))"""


def _resized(w: int, h: int) -> str:
    across, down = _LANCZOS.format(n=w), _LANCZOS.format(n=h)
    return f"""
SELECT key, CAST({h} AS INTEGER) AS height, CAST({w} AS INTEGER) AS width,
       string_agg(v || ' ' || v || ' ' || v, ' ' ORDER BY y, x) AS pixels
FROM (SELECT key, y, x, CAST(CAST(least(greatest(round_even(sum(wy * p.v * wx), 0), 0), 255) AS INTEGER) AS VARCHAR) AS v
      FROM (SELECT key, unnest(range(64)) // 8 AS sy, unnest(range(64)) % 8 AS sx, CAST(unnest(b) AS DOUBLE) AS v FROM bytes) p
      JOIN (SELECT o AS y, i AS sy, w AS wy FROM ({down})) USING (sy)
      JOIN (SELECT o AS x, i AS sx, w AS wx FROM ({across})) USING (sx)
      GROUP BY key, y, x)
GROUP BY key"""


ORACLE = {
    "read_images": f"""WITH {_BITMAP}
SELECT key, CAST(10 AS INTEGER) AS height, CAST(8 AS INTEGER) AS width, CAST(3 AS INTEGER) AS n_channels,
       CAST(list_sum(n) AS INTEGER) AS n_white,
       '000000' || array_to_string(list_transform(first, lambda v: CASE WHEN v = 1 THEN 'FFFFFF' ELSE '000000' END), '') AS first_row
FROM counts""",
    "image_vectors": _IMAGE_VECTORS,
    "image_vectors_stream": _IMAGE_VECTORS,
    "score_vectors": """
WITH v AS (SELECT vec_id AS key, unnest(range(len(embedding))) + 1 AS i, unnest(embedding) AS x FROM embeddings),
r AS (SELECT key, i, row_number() OVER (PARTITION BY key ORDER BY x DESC, i) AS rank FROM v),
e AS (SELECT key, least(30, max(CASE WHEN i = 7 THEN rank END)) AS last FROM r GROUP BY key)
SELECT key, CAST(count(*) AS INTEGER) AS n_tokens, string_agg(CAST(i AS VARCHAR), ' ' ORDER BY rank) AS tokens
FROM r JOIN e USING (key) WHERE rank <= last GROUP BY key""",
    "resize_images": f"WITH {_IMG_BYTES} SELECT * FROM ({_resized(5, 3)}) UNION ALL SELECT * FROM ({_resized(11, 12)})",
    "normalize_images": f"""WITH {_IMG_BYTES}
SELECT key, kind, CAST(height AS INTEGER) AS height, CAST(width AS INTEGER) AS width,
       CAST(3 AS INTEGER) AS channels, CAST(len(p) AS INTEGER) AS n_values,
       round(list_reduce(list_prepend(0.0::DOUBLE, p), lambda a, b: a + b), 6) AS v_sum,
       array_to_string(list_transform(p[1:3], lambda v: CAST(round(v, 6) AS VARCHAR)), ' ') AS first_pixel
FROM f""",
    "read_captions": """
SELECT CAST(conv_id AS VARCHAR) AS key, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS caption_no,
       text AS caption FROM conversations""",
    "missing_counts": """
SELECT count(*) AS rows, CAST(sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS dropped FROM conversations""",
    "by_index": """
WITH k AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS idx FROM (SELECT DISTINCT conv_id AS key FROM conversations))
SELECT conv_id AS key, turn AS caption_no, text AS caption FROM conversations
WHERE conv_id = (SELECT key FROM k WHERE idx = 3)""",
    "show_captions": f"""{_WITH}
SELECT key, caption_no, caption FROM captions WHERE key = (SELECT min(key) FROM split WHERE split = 'val')""",
    "prediction_report": f"""{_WITH},
{Q.knn_ctes(K)},
{Q.retrieve_ctes()},
pk AS (SELECT query AS key FROM best ORDER BY {Q.h('7', 'query')}, query LIMIT 5)
SELECT pk.key, b.caption AS predicted,
       (SELECT arg_min(c.caption, c.caption_no) FROM captions c WHERE c.key = pk.key) AS true_caption
FROM pk JOIN best b ON b.query = pk.key""",
    "extract_features": _FEAT_SQL,
    "extract_missing": _FEAT_SQL,
    "vocabulary_cached": f"{_WITH}, {Q.vocab_cte('train', NUM_WORDS)} SELECT word, id, n FROM vocab",
    "encode_stream": f"""{_WITH}, {Q.vocab_cte('train', NUM_WORDS)}, {Q.encode_cte('captions')}
SELECT key, caption_no, CAST(len(tokens) AS INTEGER) AS n_tokens, {Q.ids_text('tokens')} AS tokens FROM encoded""",
    "features_stream": _FEAT_SQL,
    "score_sequences": "WITH RECURSIVE" + f""" {Q.captions_cte()}, {Q.split_cte(SEED, TEST)}, {Q.train_cte()},
{Q.vocab_cte('train', NUM_WORDS)},
{Q.encode_cte('train')},
{Q.corpus_model_ctes()},
{Q.decode_ctes("(SELECT vec_id AS query FROM embeddings WHERE vec_id IN (SELECT key FROM split WHERE split = 'val'))", 30, neighbours=False)}
SELECT query AS key, CAST(len(out) AS INTEGER) AS n_tokens, array_to_string(out, ' ') AS tokens FROM decoded""",
}
