import math
import re
import zlib

import numpy as np
import pytest
import zstandard

from tablehaul.llm import language_id as L
from tests.conftest import SF


def test_held_out_texts_are_recognised(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    rows = L.languages(docs).collect()
    assert len(rows) == len(known)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [(r["lang_pred"] == known[r["id"]][0], r["rejected"]) for r in rows if r["held_out"]]
    assert np.mean([ok for ok, _ in held]) > 0.97
    assert np.mean([no for _, no in held]) < 0.02


def test_predictions_depend_on_the_text_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    contents = L.learned(docs, "doc_id", "text", "lang", 4, 2)
    plain = L.Classifier(contents)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in L.languages(docs.drop("lang", "source"), contents=contents).collect():
        assert (r["lang_pred"], r["score"], r["margin"]) == plain.predict(texts[r["id"]])


def test_the_end_of_a_long_text_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    contents = L.learned(docs, "doc_id", "text", "lang", 4, 2)
    plain = L.Classifier(contents)
    one = {r["lang"]: r["text"] for r in docs.orderBy("n_chars").collect()}
    assert plain.predict(one["de"] + " " + one["fr"] * 20)[0] == "fr"


def test_edges(edges, nothing):
    rows = L.languages(edges).collect()
    assert len(rows) == edges.count()
    texts = {r["doc_id"]: r["text"] for r in edges.collect()}
    for r in rows:
        und = r["lang_pred"] == "und"
        if r["id"] is not None:
            assert und == (not any(map(str.isalpha, texts[r["id"]] or "")))
        assert not und or (r["score"] == 0 and r["rejected"])
    assert L.languages(nothing).count() == 0
    unlearned = edges.where("doc_id IS NULL")
    assert {r["lang_pred"] for r in L.languages(unlearned).collect()} == {"und"}


def test_rows_keep_their_columns(edges, nothing):
    out = L.identified(edges)
    assert out.columns == edges.columns and out.schema == edges.schema
    kept = sorted((r["doc_id"] for r in out.collect()), key=repr)
    want = sorted((r["id"] for r in L.languages(edges).collect() if not r["rejected"]), key=repr)
    assert kept == want
    assert L.identified(nothing).count() == 0


def slow_prediction(text, contents):
    """A fresh compressor for each block and language; sizes in order of the dictionaries."""
    if not any(map(str.isalpha, text or "")):
        return "und", 0.0, 0.0
    data = re.sub(r"[\W\d_]+", " ", text).lower().encode()
    sizes = {}
    for lang, content in contents.items():
        total = 0
        for at in range(0, len(data), L.BLOCK):
            made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            made.precompute_compress(level=L.LEVEL)
            options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            total += len(zstandard.ZstdCompressor(dict_data=made, **options).compress(data[at : at + L.BLOCK]))
        sizes[lang] = total
    lang = min(sizes, key=sizes.get)
    best = sizes[lang]
    score = 1 / sum(math.exp((best - s) / (L.SCALE * best)) for s in sizes.values())
    others = [s for k, s in sizes.items() if k != lang]
    return lang, score, (min(others) - best) / best


def test_query_like_brute_force(spark, docs):
    """The registered query on a whole table, each text compressed anew."""
    from tablehaul.llm.queries import QUERIES

    contents = L.learned(docs, "doc_id", "text", "lang", 4, 2)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in QUERIES["op5_language_id"](spark, SF).collect():
        lang, score, margin = slow_prediction(texts[r["doc_id"]], contents)
        assert r["lang_pred"] == lang and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["score"] == pytest.approx(score) and r["margin"] == pytest.approx(margin)
