"""The pipeline's stages take effect, and its rows follow from what each stage kept."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def test_stages(spark):
    text = lambda i: " ".join(f"word{i} is number{k} of prose{i + k}" for k in range(16))
    near = text(1) + " tonight"
    rows = [(1, text(1), "en", "a", 9), (2, text(1) + "", "en", "b", 9), (3, near, "en", "c", 9), (4, "too short", "en", "a", 9),
            (5, text(5) + " password=hunter22x ok", "de", "a", 9), (6, text(6), None, None, None), (7, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept.append(sorted(r.doc_id for r in docs.collect()))
    assert kept == [[1, 2, 3, 5, 6], [1, 3, 5, 6], [1, 5, 6], [1, 5, 6]]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert "hunter22x" not in texts[5] and "[secret] ok" in texts[5]
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in corpus_pipeline.pack(spark, docs, "").collect():
        ids = plain.encode(texts[r.doc_id], add_special_tokens=False).ids + [1]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())


def test_near_copies_under_repeated_and_null_ids(spark):
    text = lambda i: " ".join(f"word{i} is number{k} of prose{i + k}" for k in range(16))
    rows = [(1, text(1)), (2, text(2)), (2, text(1) + " tonight"), (None, text(1) + " today"), (None, text(3)), (3, text(3) + " now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = [tuple(r) for r in corpus_pipeline.near(spark, docs, "").collect()]
    assert sorted(out, key=str) == sorted([rows[0], rows[1], rows[5]], key=str)


NAMES = ["_row", "row", "_c0", "_c1", "_words", "_lines", "_bad", "_spots", "kept", "place", "bits", "_slot", "_norm", "_sha",
         "_size", "_page", "key", "name", "spot", "hash", "_hash", "id", "secrets", "its_id", "its_hash", "__hit", "__page",
         "__slot", "clean_text", "node", "digest", "bucket", "owner", "rid", "repository"]


def test_columns_of_any_name_come_back_unchanged(spark):
    text = lambda i: " ".join(f"word{i} is number{k} of prose{i + k}" for k in range(16))
    rows = [(1, text(1), "en", "a", 5), (1, text(1), "en", "a", 5), (2, text(1) + " tonight", "en", "a", 5),
            (None, text(3) + " password=hunter22x ok", None, None, None), (4, None, "en", "b", 0), (5, "", "en", "b", 0)]
    docs = spark.createDataFrame([(*r, *[f"{n} {i}" for n in NAMES]) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"`{n}` string" for n in NAMES))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        found = out.collect()
        assert found, name
        for r in found:
            place = {r[n].removeprefix(n + " ") for n in NAMES}
            assert len(place) == 1 and rows[int(place.pop())][0] == r.doc_id, name
        docs = spark.createDataFrame(found, docs.schema)
    assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1]
    blank = docs.where("doc_id = 0")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, blank, "").collect() == [], name


def test_a_very_long_text_passes_every_stage(spark):
    long = " ".join(f"term{i} of{i % 7919}" for i in range(400_000))
    docs = spark.createDataFrame([(1, long, "en", "a", len(long)), (2, long + " end", "en", "a", len(long) + 4)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
    assert [(r.doc_id, r.n_chars) for r in docs.collect()] == [(1, len(long))]
